"""Derived inputs (from the driver tables) and plan inspection helpers."""
