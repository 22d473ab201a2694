"""Operators for training text and event sequences. Nothing else in the package imports this."""
