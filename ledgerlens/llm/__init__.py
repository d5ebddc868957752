"""Operators of a training-data pipeline, and their queries.

Nothing outside this package imports it. ``queries`` maps each ``opN_<name>``
query and ``pipeline`` to a function ``(spark, sf_dir) -> DataFrame``.
"""
