"""Operators for large text corpora: de-duplication, filtering, scoring, search and mixing."""
