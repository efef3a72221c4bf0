"""Spark operators that turn hierarchical checklists into validated Darwin Core tables."""

__version__ = "0.1.0"
