"""Incremental lakehouse marts on PySpark.

Functions build columns, operators turn DataFrames into DataFrames, plans are
the jobs that read and write tables.
"""

__version__ = "0.1.0"
