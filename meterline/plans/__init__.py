"""The five jobs, SQL views, the query registry and its DuckDB oracle."""
