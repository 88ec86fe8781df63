"""Structured Streaming forms of the validator, sessions, de-duplication, volume and carts."""
