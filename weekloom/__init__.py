"""Weekly index panels on Spark: ingest, cleaning, SQL-style reports, statistics, forecasts, segments."""
