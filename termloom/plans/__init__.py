"""Whole tasks and queries."""
