"""Click-fraud and invalid-traffic analytics on Spark DataFrames and streams."""
