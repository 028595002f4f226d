"""Survey-text analytics on Spark: DataFrames in, DataFrames out."""
