"""Analytics for video viewing events on Spark DataFrames."""
