"""Derived datasets and relational helpers; each is a function from DataFrames to a DataFrame."""
