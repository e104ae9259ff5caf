"""Operators: each takes DataFrames and returns a DataFrame; nothing here
collects data to the driver."""
