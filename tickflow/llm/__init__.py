"""Operators for training-data pipelines.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its general interface; ``queries`` registers one query per
operator, and ``corpus_pipeline.py`` at the repository top chains five of them.
"""
