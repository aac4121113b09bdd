"""Road-incident risk analytics on Spark DataFrames."""
