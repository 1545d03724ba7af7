"""Operators for preparing language-model training corpora.

Nothing outside this subpackage imports it.  Every operator is an ordinary function over
DataFrames; the thin ``opN_`` queries that fix production parameters live in ``queries``.
"""
