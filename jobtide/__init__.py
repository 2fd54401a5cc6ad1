"""Labor-market analytics on PySpark: raw feeds in, dimensions, facts and marts out."""
