"""Preparation of language-model training text: filters, de-duplication, scoring and packing."""
