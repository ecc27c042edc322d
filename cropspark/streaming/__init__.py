"""Incremental loads of newly landed files."""
