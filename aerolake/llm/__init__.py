"""Operators for text corpora and record survivorship: consensus (2), encoding (8), leakage (9), truncation (10).

Nothing outside this package imports it.
"""
