"""Metrics: functions from DataFrames to a DataFrame."""
