"""Operators of a training-data pipeline.

Nothing else in the library imports this package.  Each module holds one
operator with its own interface; ``queries`` applies them to the benchmark
tables.
"""
