"""Bindings of the library to the given tables, and the registry of checked queries."""
