"""Water-resources analytics on Spark DataFrames."""
