"""Composite plans: metric series, merges, entity resolution, reports."""
