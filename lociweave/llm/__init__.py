"""Operators for large text collections: extraction, classification, privacy, decontamination, tokens, duplicates.

Nothing else in the library imports this package.
"""
