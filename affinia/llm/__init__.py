"""Operators for preparing language-model training data. Nothing else in affinia needs them."""
