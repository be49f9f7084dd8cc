"""Bronze contract, feeds and layer tables."""
