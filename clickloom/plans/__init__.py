"""Queries over the provided tables, each with the SQL it must agree with."""
