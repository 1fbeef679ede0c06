"""Validated, layered data processing and batch text retrieval as Spark DataFrame operators."""
