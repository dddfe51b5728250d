"""Layered (bronze, silver, quality, gold, reporting) data jobs on plain Spark.

Every operator is a function from DataFrames to a DataFrame: it declares a
plan and leaves strategy, pushdown and runtime re-planning to Catalyst and AQE.
"""
