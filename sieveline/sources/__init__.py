"""Schemas, landing readers, derived test tables, registry storage and exports."""
