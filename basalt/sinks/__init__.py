"""Sinks: overwrite writers, text dumps, coefficient tables."""
