"""Estate inventory, dependency and data-quality jobs on Spark DataFrames."""
