"""Training-data operators: deduplication, filtering, mixing and extraction on Spark DataFrames."""
