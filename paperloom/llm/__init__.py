"""Operators on text corpora. Nothing outside this sub-package imports it."""
