"""Aggregates, rankings and the few sequence operators."""
