"""Operators for large training-text tables, their queries and SQL twins."""
