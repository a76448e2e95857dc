"""Operators for preparing text corpora for language-model training; nothing else in the library imports them."""
