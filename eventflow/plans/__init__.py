"""Whole jobs and the registered query catalogue."""
