"""Spark jobs for multi-resolution volumes, their logs, and text corpora."""

__version__ = "0.3"
