"""Operators of a training-data pipeline, and the queries that apply them.

Nothing outside this subpackage (and corpus_pipeline.py at the repository top)
imports it.
"""
