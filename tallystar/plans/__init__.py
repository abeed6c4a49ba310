"""Whole pipelines and analytical queries."""
