"""Star-schema analytics over street-activity event extracts, on Spark DataFrames."""
