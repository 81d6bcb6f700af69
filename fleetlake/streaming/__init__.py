"""streaming layer."""
