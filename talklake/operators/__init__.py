"""Operators: functions from DataFrames to DataFrames.

They run no jobs, but for two that need a size first: ``number_rows`` counts its keys and
``vectors.top_k`` reads the queries in chunks of bounded size.
"""
