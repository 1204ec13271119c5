"""Incremental checking of newly landed files."""
