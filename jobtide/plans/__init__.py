"""The tables: dimensions, enriched postings, facts, marts, reports and checks."""
