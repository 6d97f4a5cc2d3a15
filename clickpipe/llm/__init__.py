"""Training-data operators: search, deduplication, extraction, mixing, tokens, quality.

Nothing else in the library imports this subpackage; ``queries.py`` holds the
registered queries.
"""
