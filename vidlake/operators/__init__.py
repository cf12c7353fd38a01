"""Relational operators over the silver fact table."""
