"""Structured Streaming form of the incremental price refresh."""
