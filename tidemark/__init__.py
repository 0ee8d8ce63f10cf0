"""tidemark: monthly-snapshot credit analytics as lazy Spark DataFrame operators."""
