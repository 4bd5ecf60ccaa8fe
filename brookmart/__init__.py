"""Streaming and batch warehouse for an online shop, built on Spark SQL.

Every operator is a function from DataFrame to DataFrame.  Nothing runs until
the caller acts on the result, except where a docstring says a table is written.
"""
