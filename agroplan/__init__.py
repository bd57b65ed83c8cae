"""Harvest planning operators on Spark DataFrames."""
