"""Whole questions put together from operators."""
