"""Operators for large text corpora. ``queries`` registers one query for each of them.

Every operator takes a DataFrame with any further columns; those never meet the operator's own
column names, because rows travel as one struct where helper columns are needed.
"""
