"""Readers of event logs, change logs, lake tables and relational tables."""
