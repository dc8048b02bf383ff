"""Assembled plans and the registry of queries."""
