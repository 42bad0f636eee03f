"""Operators for large text corpora, each on its own table of documents or pages.

Nothing else in the library imports this subpackage.
"""
