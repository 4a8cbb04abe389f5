"""Feeds, files and tables."""
