"""Siltworks: a Spark-first engine for turning raw source-code datasets into a clean, auditable corpus."""

__version__ = "0.1.0"
