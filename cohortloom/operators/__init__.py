"""Operators on cohort tables: every function takes DataFrames and returns a lazy DataFrame."""
