"""Feature, model and recommendation jobs on Spark DataFrames."""
