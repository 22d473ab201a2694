"""Readers of raw input."""
