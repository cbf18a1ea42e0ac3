"""Structured Streaming extensions."""
