"""Operators for preparing training text.

Each module holds one operator with its own general interface.  ``queries.py`` holds the thin
``opN_*`` queries and their SQL.  Nothing else in the package imports this subpackage.
"""
