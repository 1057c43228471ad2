"""User-behaviour analytics on PySpark: every operator maps DataFrames to DataFrames."""

__version__ = "0.1.0"
