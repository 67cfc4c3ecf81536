"""Operators for training-data pipelines: scoring, deduplication, scanning,
tokenisation and packing of documents.  Nothing else in the library imports
this subpackage."""
