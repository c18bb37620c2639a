"""Change-data, history and data-security operators for Spark DataFrames.

Everything takes and returns plain DataFrames (or streams of them); the tables
that travel between the operators are described in ``changeflow.contracts``.
"""
