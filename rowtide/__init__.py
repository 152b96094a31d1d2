"""Rowtide: change feeds to trustworthy tables, on Spark."""
