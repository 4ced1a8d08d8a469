"""Operators for preparing training data: tokens, languages, quality, duplicates, packing."""
