"""Market-price analytics on PySpark: sources, cleaning, quality checks, star schema, queries."""
