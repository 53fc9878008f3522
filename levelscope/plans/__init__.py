"""Operators composed into the two pipelines."""
