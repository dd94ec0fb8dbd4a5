"""User-level data operators and ready-made jobs on Spark DataFrames."""
