"""Genome-map stitching analytics on Spark DataFrames."""
