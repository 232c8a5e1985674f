"""Composite jobs (user-level entry points) and the registered queries."""
