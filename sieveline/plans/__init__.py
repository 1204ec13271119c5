"""Whole jobs and read-only reports composed from the operators."""
