"""Sequence analytics on Spark: batch, SQL and streaming operators over DataFrames."""
