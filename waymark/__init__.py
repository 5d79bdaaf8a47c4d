"""City-knowledge analytics on PySpark."""
