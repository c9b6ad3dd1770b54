"""Continuous ingest of landed payloads."""
