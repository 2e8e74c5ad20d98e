"""Training-data operators: quality, language, deduplication, privacy, tokenisation.

Nothing else in the library imports this subpackage.
"""
