"""State over append-only logs, in batch and as streams."""
