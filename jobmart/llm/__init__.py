"""Operators for large-scale training-data pipelines.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries when
the package is present.  One module per operator, ``catalog`` registers the queries.
"""
