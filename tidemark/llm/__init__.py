"""Operators for preparing training data: filtering, de-duplication, mixing, packing, search and files."""
