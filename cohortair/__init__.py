"""Spark operators for study cohorts and the environment around them.

Every operator is a plain function from DataFrames to a DataFrame.
"""
