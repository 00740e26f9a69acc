"""Operators of the package."""
