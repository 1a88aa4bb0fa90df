"""Record linkage and master data on Spark: DataFrames in, DataFrames out."""
