"""Operators for preparing training text: mixing, cleaning, de-duplicating, scoring, packing."""
