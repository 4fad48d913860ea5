"""Operators for training-data pipelines: one module per operator, one registry.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries
when the package is present.
"""
