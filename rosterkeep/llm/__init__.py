"""Operators for preparing training text: search, cleaning, scoring and packing of documents."""
