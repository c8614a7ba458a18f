"""Passage analytics for tagged individuals on Spark DataFrames."""
