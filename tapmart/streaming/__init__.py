"""Streaming loads."""
