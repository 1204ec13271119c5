"""Checks, de-duplication, constraint gate, issue lifecycle and maintenance."""
