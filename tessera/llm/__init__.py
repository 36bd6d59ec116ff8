"""Training-data operators: deduplication, scanning, quality, mixing, scoring, tokenising.

Each module holds one operator; ``queries.py`` registers them.  Nothing
outside this package imports it.
"""
