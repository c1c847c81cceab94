"""Operators for cleaning and shaping training text; nothing else in the library imports them."""
