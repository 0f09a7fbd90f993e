"""Record, table and quality operators: DataFrame in, DataFrame out."""
