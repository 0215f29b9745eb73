"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it. Each module holds one operator with its own interface;
``queries`` holds the thin registered queries and their SQL.
"""
