"""Operators: functions from DataFrames to a DataFrame, grouped by area."""
