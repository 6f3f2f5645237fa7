"""Verb conjugation tables as Spark DataFrame jobs: extraction, merging, star schema, queries, review."""
