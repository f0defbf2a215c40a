"""Operators for training-data text; nothing else in the package imports this."""
