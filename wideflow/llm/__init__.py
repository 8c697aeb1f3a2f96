"""Operators for preparing language-model training data.

One module per operator, each with a general interface on DataFrames; the thin
driver queries are in ``queries`` and the staged run in ``corpus_pipeline.py`` at the
repository top. Nothing else in the library imports this package.
"""
