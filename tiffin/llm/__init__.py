"""Operators that prepare training data. Nothing else in the library imports this package."""
