"""Column functions: everything here builds Spark expressions (one Arrow function: Fisher's test)."""
