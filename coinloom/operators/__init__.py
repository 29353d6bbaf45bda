"""Ledger operators, each a function from DataFrames to a DataFrame over whole tables."""
