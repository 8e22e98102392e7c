"""The months of the given tables."""

from datetime import date

START, END, BOUNDARY_END = date(1995, 1, 1), date(2001, 8, 1), date(2001, 10, 1)
COHORT = date(2001, 7, 1)
