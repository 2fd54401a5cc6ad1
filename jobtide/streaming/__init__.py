"""Incremental landing of daily files."""
