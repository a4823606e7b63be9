"""Scans, message and page readers, sinks."""
