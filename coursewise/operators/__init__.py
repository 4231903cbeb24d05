"""coursewise.operators."""
