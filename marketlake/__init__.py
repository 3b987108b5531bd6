"""Marketplace lakehouse on Spark: raw marketplace tables -> cleaned -> star schema -> KPIs.

Every builder is a pure function from DataFrames to a DataFrame; only the
pipeline writers and the quality gate trigger Spark actions.
"""

__version__ = "0.1.0"
