"""Building blocks on DataFrames."""
