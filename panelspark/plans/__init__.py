"""Whole runs: from facts and dimensions to stored panels."""
