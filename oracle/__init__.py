"""Reference answers as plain SQL over the same source tables, for DuckDB."""
