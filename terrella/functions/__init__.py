"""Column builders. All are native expressions, none is a Python UDF."""
