"""Whole pipelines over the loan table."""
