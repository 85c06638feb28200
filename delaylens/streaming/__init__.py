"""Structured Streaming feeds for observations and forecasts."""
