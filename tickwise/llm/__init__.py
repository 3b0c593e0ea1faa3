"""Operators and queries for large-scale training-data pipelines.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its
queries only when it is present.
"""
