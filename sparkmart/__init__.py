"""sparkmart: a retail warehouse built from Spark DataFrame operations."""
