"""functions layer."""
