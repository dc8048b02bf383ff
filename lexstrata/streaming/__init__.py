"""Streaming runs."""
