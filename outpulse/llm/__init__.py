"""Operators that prepare a training corpus; nothing outside this package imports it."""
