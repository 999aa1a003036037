"""Structured Streaming forms of the monitoring and loading operators."""
