"""Operators of a training-data pipeline over text, chat and vector tables."""
