"""Streaming jobs and the sinks they write to."""
