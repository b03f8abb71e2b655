"""Structured Streaming: topic messages -> landing table."""
