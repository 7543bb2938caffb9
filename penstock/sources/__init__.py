"""Where the DataFrames come from."""
