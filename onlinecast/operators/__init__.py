"""Operators on readings, windows, models and results."""
