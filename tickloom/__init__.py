"""tickloom: market-data replay, quality and catalog operators on Spark DataFrames."""
