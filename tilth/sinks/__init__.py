"""sinks of tilth."""
