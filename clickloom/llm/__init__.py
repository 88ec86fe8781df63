"""Operators on training text: ten of them, and the queries that apply them."""
