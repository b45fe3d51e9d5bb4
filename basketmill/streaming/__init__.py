"""Structured Streaming forms of the rule gate and of stock reservation."""
