"""Build and check training sets of source code with Spark DataFrames."""
