"""Query definitions over the driver's tables (Spark side and DuckDB oracle side)."""
