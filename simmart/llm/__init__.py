"""Operators for preparing training text: thirteen of them, one module each."""
