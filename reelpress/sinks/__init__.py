"""Sinks of the library."""
