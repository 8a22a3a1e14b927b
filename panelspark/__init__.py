"""Health-plan membership and quality-measure analytics on Spark DataFrames."""
