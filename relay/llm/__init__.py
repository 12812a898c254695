"""Operators over a text corpus, for preparing training data."""
