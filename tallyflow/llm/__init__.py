"""Operators of a training-data pipeline and their named queries."""
