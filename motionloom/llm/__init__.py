"""Operators for preparing language-model training data; queries over the given tables are in ``queries``."""
