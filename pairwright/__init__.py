"""User-item matching and recommendation analytics as Spark DataFrame operators."""
