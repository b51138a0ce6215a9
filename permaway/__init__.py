"""Map-feature and rail-network analytics on Spark DataFrames."""
