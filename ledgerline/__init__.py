"""Batch analytics over account transactions, built from Spark DataFrame operators.

Every operator takes and returns DataFrames and stays lazy unless its
docstring names the action it runs.  The caller owns the session.
"""
