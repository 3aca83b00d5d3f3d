"""Registered queries with their oracle statements, by area."""
