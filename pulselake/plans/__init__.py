"""Composed batch flows and the query registry."""
