"""Structured Streaming jobs over log lines, manifests and arriving articles."""
