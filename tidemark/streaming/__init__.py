"""Keeping the derived tables up to date as bars arrive."""
