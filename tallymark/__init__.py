"""Catalogue analytics as lazily built Spark DataFrames."""
