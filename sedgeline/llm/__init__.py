"""Operators that prepare text corpora for model training; nothing else in the package imports them."""
