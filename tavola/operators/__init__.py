"""Analytics operators: DataFrames in, lazy DataFrame out."""
