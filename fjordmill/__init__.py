"""Spark-first analytics for donated web activity: URL algebra, moments, classification, dedup, merging and reports."""

__version__ = "0.1.0"
