"""Operators for large training corpora.

Nothing else in the package imports this folder; it can be deleted as a whole.
"""
