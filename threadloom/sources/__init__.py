"""Readers: flat comments, relational tables, nested documents, catalog, test mapping."""
