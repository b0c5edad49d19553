"""Operators that prepare training text: dedup, decontamination, identification, scoring and packing."""
