"""Operators of a training-data pipeline, one module each, and their registered queries.

Nothing outside this subpackage imports it, apart from ``__spark_entry__.py`` (guarded)
and ``corpus_pipeline.py``.
"""
