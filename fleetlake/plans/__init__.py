"""plans layer."""
