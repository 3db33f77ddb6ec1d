"""Whole jobs put together from operators: fetch, search, push, validate."""
