"""Operators of a training-data pipeline over web-scale text tables."""
