"""Query catalog, DuckDB oracle, the three jobs and stage audit."""
