"""Structured Streaming sources, sinks and checks."""
