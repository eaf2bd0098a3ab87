"""panelspark.plans: the query registry (key -> Spark callable, oracle SQL)
and the reporting conventions shared by Spark and the DuckDB oracle."""
