"""Clickstream quality, sessions and marketing attribution as Spark DataFrame operators."""

from clickloom.config import PANDAS, SQL, Settings

__all__ = ["PANDAS", "SQL", "Settings"]
