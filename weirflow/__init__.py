"""weirflow: user-level data operators for batch and streaming work on Spark DataFrames."""
