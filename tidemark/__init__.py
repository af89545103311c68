"""Feature-drift analytics and data preparation on Spark DataFrames."""
