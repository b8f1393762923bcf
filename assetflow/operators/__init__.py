"""Relational operators of the analytics, each a DataFrame -> DataFrame function."""
