"""Streaming forms of stages."""
