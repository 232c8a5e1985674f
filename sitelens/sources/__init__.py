"""Readers with explicit schemas and contracts, writers, source profiles."""
