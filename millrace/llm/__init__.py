"""Operators that prepare training text; nothing else in the package depends on them."""
