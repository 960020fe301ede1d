"""Composed plans: pipelines per profile, table load, size-checked joins, the query
registry and its DuckDB oracles."""
