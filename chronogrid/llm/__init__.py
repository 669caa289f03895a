"""Operators of a training-data pipeline, as Spark jobs over text, page and vector tables."""
