"""Queries and multi-step jobs."""
