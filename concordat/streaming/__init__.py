"""Structured Streaming: arriving rows against settled state. An addition to the batch engine."""
