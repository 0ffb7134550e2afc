"""Operators for cleaning and weighing training text; nothing else in the library imports them."""
