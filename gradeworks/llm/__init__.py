"""Operators that prepare text, pages and vectors for training large language models.

Nothing else in the library imports this subpackage.
"""
