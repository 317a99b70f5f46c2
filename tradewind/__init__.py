"""Commerce warehouse and metrics on Spark DataFrames."""
