"""Readers of the tables and of the text formats."""
