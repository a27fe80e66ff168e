"""Operators that prepare large text corpora for training.

Each module holds one operator with its own general interface; ``queries`` binds them to the
tables.  Nothing else in the package imports this one.
"""
