"""Reads: landed payload text, nested-JSON extraction, locations, keyed tables."""
