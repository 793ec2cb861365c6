"""Trip-tip analytics and a query catalogue for Spark DataFrames, SQL and streams."""
