"""DuckDB statements that check the Spark metrics on the star tables."""
