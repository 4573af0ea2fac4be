"""Training-data operators: packing, deduplication, search, classification, extraction and filtering.

Nothing else in the library imports this package; it can be deleted as a whole.
"""
