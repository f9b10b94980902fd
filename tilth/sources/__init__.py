"""sources of tilth."""
