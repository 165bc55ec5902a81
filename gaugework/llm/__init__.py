"""Operators for preparing language-model training data, and the queries that apply them.

Nothing outside this package (and ``corpus_pipeline.py``, which counts as part of it) imports it."""
