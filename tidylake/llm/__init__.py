"""Operators of a training-data pipeline.

Each module holds one operator with its own general interface; ``queries``
holds the thin registered queries and their SQL.  Nothing else in the library
imports this subpackage.
"""
