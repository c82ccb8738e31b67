"""Structured Streaming form of the cleaning rules and its sinks."""
