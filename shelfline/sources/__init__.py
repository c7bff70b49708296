"""Typed sources and sinks."""
