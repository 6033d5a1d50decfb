"""Training-data operators: extraction, deduplication, tokenisation, packing.

Nothing else in the library imports this subpackage.
"""
