"""Streaming."""
