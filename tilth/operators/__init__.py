"""operators of tilth."""
