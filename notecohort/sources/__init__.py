"""Readers (A1-A7) and sinks."""
