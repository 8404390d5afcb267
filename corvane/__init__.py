"""Corvane: provenance-preserving corpus engineering on Spark DataFrames."""
