"""Winter road-hazard forecasting on Spark DataFrames."""
