"""Taxaloom: multi-source species metadata integration and querying on Spark."""

__version__ = "0.1.0"
