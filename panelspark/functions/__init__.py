"""Scalar column functions: calendar, numbers, text."""
