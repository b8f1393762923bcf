"""Operators for preparing language-model training data, each a set of Spark jobs.

Nothing else in the library imports this subpackage; ``registry`` lists its queries.
"""
