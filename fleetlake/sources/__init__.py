"""sources layer."""
