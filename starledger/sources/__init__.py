"""Batch tables: reading, writing, and the item file."""
