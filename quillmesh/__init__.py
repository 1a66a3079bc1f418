"""Batch analytics over text, graphs and labelled vectors, as Spark DataFrames."""
