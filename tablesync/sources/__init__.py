"""Scans and sources."""
