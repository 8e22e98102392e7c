"""Subscription revenue metrics as PySpark DataFrame functions.

Every operator takes DataFrames and returns a lazy DataFrame built from Spark's
own expressions, so callers compose, filter, persist and write results as they
would any other DataFrame.
"""
