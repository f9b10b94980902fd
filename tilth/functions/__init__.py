"""functions of tilth."""
