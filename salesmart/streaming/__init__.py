"""Structured Streaming: the speed view and the batch + speed serving view."""
