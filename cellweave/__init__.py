"""Analysis of spatial cell tables on Spark DataFrames."""
