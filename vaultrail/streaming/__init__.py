"""Structured Streaming jobs, each the stream twin of a batch operator."""
