"""coursewise.streaming."""
