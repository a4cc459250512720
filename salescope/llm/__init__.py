"""Operators for preparing language-model training data.

Each module holds one operator; ``queries.py`` binds them to the given tables.
Nothing else in the library imports this subpackage.
"""
