"""Operators for preparing language-model training data.

Each module holds one operator; ``queries`` binds them to the test tables.
Nothing outside this package imports it.
"""
