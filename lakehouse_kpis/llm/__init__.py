"""Operators of a training-data pipeline: extraction, cleaning, de-duplication, mixing, tokens."""
