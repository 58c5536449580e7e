"""Operators of a training-data pipeline: dedup, mixing, packing, scoring, search.

Each module holds one operator with its own general interface; ``queries``
maps the operators onto the test tables. Nothing else in the library
imports this package.
"""
