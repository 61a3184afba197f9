"""Operators for preparing language-model training corpora (see queries.py)."""
