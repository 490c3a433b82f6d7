"""Operators for preparing language-model training data.

Ten operators over documents, web pages and conversations, each in a module
of its own with a general interface, and the thin queries that bind them to
the driver tables (``queries.py``).  Nothing else in the library imports this
subpackage.
"""
