"""Operators for building training data from web text; nothing else in the library imports them."""
