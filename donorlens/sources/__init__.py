"""Readers and adapters: driver tables and CSV exports onto the canonical frames."""
