"""Composition: the mart plan, the refresh pipeline, the registered queries and their oracle SQL."""
