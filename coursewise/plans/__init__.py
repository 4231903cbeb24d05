"""coursewise.plans."""
