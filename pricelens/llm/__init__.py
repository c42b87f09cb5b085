"""Operators of a training-data pipeline: filters, duplicates, mixing, search, tokens, shards.

Nothing outside this package imports it. Each module holds one operator with its own general
interface; ``queries.py`` derives the registered ``opN_...`` queries from them.
"""
