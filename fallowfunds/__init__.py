"""Spark jobs that turn semi-annual lists of unclaimed deposits into a canonical data set."""

__version__ = "0.1.0"
