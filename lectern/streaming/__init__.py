"""Structured Streaming counterparts."""
