"""Continuous intake of files."""
