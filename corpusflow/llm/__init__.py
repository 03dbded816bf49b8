"""Operators of a large-scale training-data pipeline and their queries."""
