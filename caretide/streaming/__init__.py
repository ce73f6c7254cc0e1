"""Structured Streaming counterparts of the daily batch runs."""
