"""Retail demand analytics on Spark DataFrames."""
