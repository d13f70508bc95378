"""Sources: every one carries a deterministic ord."""
