"""Readers and writers: event text, topics, inventory files, landing and core tables."""
