"""coursewise.sources."""
