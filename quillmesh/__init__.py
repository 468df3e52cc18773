"""Text-to-star-schema analytics on Spark DataFrames."""
