"""Operators for preparing training text: counting, filtering, mixing,
deduplicating, searching, encoding and scoring documents.

Nothing else in the library imports this subpackage.  Every module holds one
operator with its own interface; ``queries`` registers one thin query for each.
"""
