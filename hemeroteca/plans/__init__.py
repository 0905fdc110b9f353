"""Whole workflows, and the catalogue of runnable queries with their checks."""
