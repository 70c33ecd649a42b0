"""Operators for training-data pipelines: one module each, their queries in ``queries`` and their SQL in ``oracle``."""
