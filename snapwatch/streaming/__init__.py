"""Structured Streaming: continuous insert-unique, running counters and the daily cut-off."""
