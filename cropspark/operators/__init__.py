"""Table operators: parameterised functions from DataFrames to DataFrames."""
