"""Operators for building training corpora from very large tables of text."""
