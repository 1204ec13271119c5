"""Sieveline: rule-based data-quality checking of very large health tables on Spark."""
