"""Column-level building blocks: plain functions that return a ``Column``."""
