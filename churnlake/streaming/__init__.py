"""Structured Streaming: the same operators over rows as they arrive."""
