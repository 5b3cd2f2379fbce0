"""Operators of training-data pipelines: one module each, and their queries in ``catalog``."""
