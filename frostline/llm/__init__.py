"""Operators for building training text at scale."""
