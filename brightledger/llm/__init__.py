"""Operators for training data: name mapping, duplicates, entity links, tokens, leaks, sentences."""
