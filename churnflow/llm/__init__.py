"""Operators of a training-data pipeline: duplicates, leaks, secrets, personal data, quality, language, tokens."""
