"""starloom: data-engineering operators and analytics on Spark DataFrames."""
