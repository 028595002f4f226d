"""Reusable plan shapes: range splits, skew handling, lineage cuts, jobs."""
