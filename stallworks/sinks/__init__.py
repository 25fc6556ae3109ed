"""Idempotent writes."""
