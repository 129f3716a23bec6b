"""Operators for training data: texts, token ids and vectors. Nothing outside this package imports it."""
