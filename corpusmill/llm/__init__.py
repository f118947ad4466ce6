"""Operators for building language-model training data at scale.

Nothing else in the library imports this subpackage; it can be removed with its
tests and ``corpus_pipeline.py``.
"""
