"""Operators on text corpora: cleaning, de-duplication, scoring and packing of training documents."""
