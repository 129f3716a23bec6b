"""Bronze -> silver -> star schema on Spark DataFrames."""
