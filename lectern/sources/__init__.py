"""Scans, parsers of source files, and sinks."""
