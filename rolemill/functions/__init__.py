"""."""
