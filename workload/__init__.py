"""The operators run on the bundled test tables, with DuckDB text to check them."""
