"""Operators for preparing text and vector corpora.

Each module holds one operator with its own general interface; the thin
driver queries are in ``queries``.  Nothing else in the library imports
this subpackage.
"""
