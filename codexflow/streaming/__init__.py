"""Incremental and streaming runs."""
