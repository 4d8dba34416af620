"""Operators for preparing language-model training data; nothing outside this package imports it."""
