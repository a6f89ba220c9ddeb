"""Independent SQL oracle (DuckDB dialect) for the Spark queries."""
