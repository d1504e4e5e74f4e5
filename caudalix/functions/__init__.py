"""Part of caudalix."""
