"""Registered queries over the given tables, and the independent SQL each is compared with."""
