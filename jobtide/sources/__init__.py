"""Readers and writers around the layers raw, bronze, silver and gold."""
