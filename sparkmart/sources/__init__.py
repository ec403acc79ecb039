"""Reading delimited files, writing batches and publishing tables."""
