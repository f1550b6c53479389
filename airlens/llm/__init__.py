"""Operators for preparing training data: quality, extraction, duplicates, packing, scoring."""
