"""Spark-first curation, deduplication and labelling of text collections."""
