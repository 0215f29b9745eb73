"""Relational operators of the corpus engine."""
