"""Operators of a training-data pipeline over document tables.

Nothing outside this package imports it.  Every module states its results for
nulls, empty texts, ties and repeated rows in its docstring.
"""
