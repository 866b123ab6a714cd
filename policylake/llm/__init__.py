"""Operators of a training-data pipeline: language, duplicates, quality, extraction, search and mixing."""
