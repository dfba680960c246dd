"""Operators for preparing language-model training data.

Each module holds one operator with a general DataFrame interface;
``queries`` holds the thin named queries over the driver's tables. Nothing
outside this package imports it.
"""
