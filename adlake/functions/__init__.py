"""Column expressions: everything here is a built-in Spark expression, nothing is a Python UDF."""
