"""Operators for preparing a text corpus; nothing else in the library imports them."""
