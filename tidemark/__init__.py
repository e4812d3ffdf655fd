"""Market-data quality and feature engine on Spark DataFrames."""
