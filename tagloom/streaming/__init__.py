"""Change streams and their state."""
