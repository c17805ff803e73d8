"""SQL statements of the same results, for the side-by-side check in DuckDB."""
