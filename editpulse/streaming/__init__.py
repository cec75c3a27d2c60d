"""Structured Streaming: the edit-count job and its sinks."""
