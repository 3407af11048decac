"""Operators for preparing training text: mixing, language, tokens, duplicates, quality, search, pages.

Nothing outside this package and ``corpus_pipeline.py`` imports it.
"""
