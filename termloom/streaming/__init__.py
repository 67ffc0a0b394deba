"""Arriving documents."""
