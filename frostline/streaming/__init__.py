"""Scoring readings as they arrive."""
