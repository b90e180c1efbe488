"""Operators for preparing training text. Nothing else in the library imports this package.

Texts come from any table with a text column; a NULL text counts as empty everywhere.
"""
