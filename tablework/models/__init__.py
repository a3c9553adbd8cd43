"""Spark ML estimators and training pipelines."""
