"""Operators on texts and vectors for training data; nothing else in the library imports them."""
