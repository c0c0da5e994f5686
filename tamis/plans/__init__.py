"""Operators composed into layers, and the bindings that run them on the provided tables."""
