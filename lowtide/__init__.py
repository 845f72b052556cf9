"""lowtide: low-value-care measurement over claims tables, on Spark DataFrames."""
