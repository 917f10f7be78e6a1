"""Operators for preparing text corpora at scale.

Each module holds one operator with a general interface; ``queries`` applies
them to the given tables.  Nothing else in the library imports this package.
"""
