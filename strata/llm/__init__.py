"""Training-data operators: deduplication, sharding, tokenisation, WARC,
decontamination, toxicity and exact vector search over ``documents``-like tables.

Nothing else in the library imports this subpackage.
"""
