"""metaseries: measurement-series analytics on Spark."""
