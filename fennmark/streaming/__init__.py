"""Streaming of the library."""
