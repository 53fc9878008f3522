"""Readers, input gates and writers."""
