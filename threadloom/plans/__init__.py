"""Stored working tables and the registry of runnable queries."""
