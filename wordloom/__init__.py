"""Statistics of large text corpora as plain Spark DataFrames."""
