"""Operators for training text: near-duplicates, encoding, mixing, sentences.

Nothing else in the library imports this subpackage.
"""
