"""Training-data operators: extraction, dedup, tokens, filters, search.

Nothing else in the library imports this subpackage.
"""
