"""Whole queries and their SQL twins."""
