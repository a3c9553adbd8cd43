"""Readers for files, landed pages and tables."""
