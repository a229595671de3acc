"""Whole jobs, and the given tables turned into panels."""
