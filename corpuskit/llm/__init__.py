"""Training-data operators: deduplication, decontamination, filtering, extraction, packing and output.

Nothing else in the library imports this subpackage; it imports nothing from the rest of the library either.
"""
