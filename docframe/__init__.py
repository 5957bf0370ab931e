"""Search, facet and maintain large document tables with plain Spark DataFrames."""
