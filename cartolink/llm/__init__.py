"""Operators that a training-data pipeline over text needs.

Nothing outside this package imports it.  ``registry`` holds the queries and
their SQL; the operators themselves are one module each.
"""
