"""Operators for training-data pipelines over very large document tables.

Nothing outside this package imports it; see ``queries`` for the registered queries.
"""
