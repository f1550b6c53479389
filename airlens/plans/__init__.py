"""Whole jobs put together from operators, and the catalogue of named queries."""
