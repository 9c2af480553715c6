"""The library at work on the benchmark tables; each query has a DuckDB counterpart."""
