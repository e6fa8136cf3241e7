"""Table operators: DataFrames in, DataFrame out, nothing collected."""
