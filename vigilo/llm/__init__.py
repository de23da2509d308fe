"""Operators of a training-data pipeline over the tables ``documents`` and ``embeddings``.

Nothing else in the library imports this subpackage; ``corpus_pipeline.py`` at the
repository top chains five of the operators into one pipeline.
"""
