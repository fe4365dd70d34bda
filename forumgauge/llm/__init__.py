"""Operators on training text: scoring, scanning, mixing, de-duplication, tokens, extraction."""
