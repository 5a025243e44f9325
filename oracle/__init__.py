"""SQL twins of the registered queries, run by DuckDB over the same files."""
