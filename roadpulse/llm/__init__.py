"""Operators for large text corpora, each a Spark job over a table of documents."""
