"""Time-series cleaning, alignment, feature building and forecasting on Spark DataFrames."""
