"""Structured Streaming forms of the pooled estimates."""
