"""Structured Streaming forms of the fusion and session operators."""
