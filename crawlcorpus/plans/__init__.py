"""Whole jobs, and the physical choices they share."""
