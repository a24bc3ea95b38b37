"""Whole queries: star schema, lake loading, synthetic tables, and the registry."""
