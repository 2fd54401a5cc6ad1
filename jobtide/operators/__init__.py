"""DataFrame-level building blocks; keys and values are column names, so they fit any table."""
