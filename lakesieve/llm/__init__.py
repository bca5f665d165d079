"""Operators for large training corpora, each over whole tables and whole texts."""
