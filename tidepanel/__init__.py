"""Monthly-snapshot panel analytics on Spark DataFrames."""
