"""Naive-Bayes text classification and star-schema analytics as Spark jobs."""
