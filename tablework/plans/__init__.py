"""Registered queries on the shared test tables, each beside its SQL answer."""
