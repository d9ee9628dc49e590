"""Structured Streaming front end of the monthly refresh."""
