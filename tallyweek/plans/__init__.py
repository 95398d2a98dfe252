"""Whole pipelines."""
