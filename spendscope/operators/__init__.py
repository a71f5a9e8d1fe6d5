"""DataFrame operators: each takes DataFrames and parameters, returns a DataFrame."""
