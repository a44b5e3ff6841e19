"""Payroll operators, each from DataFrames to a DataFrame."""
