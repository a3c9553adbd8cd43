"""Batch and streaming work on tables, written as DataFrame-to-DataFrame functions."""
