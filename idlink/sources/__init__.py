"""Readers, canonical conforming and sinks."""
