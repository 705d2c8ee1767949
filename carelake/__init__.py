"""Encounter analytics on Spark DataFrames."""
