"""Joins, windows, aggregates and neighbour search as DataFrame functions."""
