"""Layered trip analytics on Spark DataFrames: bronze, silver, gold, quality and product queries."""
