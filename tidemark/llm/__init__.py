"""Operators of a large-scale training-data pipeline.

Nothing outside this subpackage imports it; ``queries.py`` registers the
queries of these operators and their SQL.
"""
