"""Readers of topics, tables and archives."""
