"""Portfolio operators: DataFrame in, DataFrame out."""
