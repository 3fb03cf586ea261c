"""Batch jobs that chain operators and write their results."""
