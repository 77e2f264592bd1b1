"""Keeps mart tables in step with operational tables from a change-message stream."""

__version__ = "0.1.0"
