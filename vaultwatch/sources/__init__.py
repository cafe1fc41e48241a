"""Readers, topics and result files."""
