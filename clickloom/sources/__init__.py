"""Readers of event files and tables, writers, quarantine and incremental load."""
