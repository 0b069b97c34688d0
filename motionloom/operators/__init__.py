"""Operators over all recordings at once: DataFrame in, DataFrame out."""
