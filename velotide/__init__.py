"""Shared-mobility analytics on Spark DataFrames.

Every operator is a plain function from DataFrames to a DataFrame; sources and
sinks take the session and a path.  ``velotide.registry`` wires the operators to
the test tables, next to the SQL each one is checked against.
"""
