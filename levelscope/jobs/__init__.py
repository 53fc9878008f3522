"""Submit scripts."""
