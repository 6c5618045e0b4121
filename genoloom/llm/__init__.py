"""Training-data operators: one module per operator, each a function over DataFrames."""
