"""operators layer."""
