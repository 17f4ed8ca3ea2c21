"""Event-study analytics on price bars, expressed as Spark DataFrame operations."""

from tidemark.grid import Grid

__all__ = ["Grid"]
