"""Readers and writers: dumps, daily facts, raw assets and named tables."""
