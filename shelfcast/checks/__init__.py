"""Reference SQL (DuckDB dialect) for the registered queries: the same
semantics written independently as plain SQL over the benchmark tables."""
