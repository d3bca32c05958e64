"""Daily price-bar analytics and model comparison on Spark DataFrames."""
