"""Operators that prepare texts and vectors for training language models.

Each module holds one operator with a general interface; ``queries`` applies them to the given
tables.  Nothing outside this package imports it.
"""
