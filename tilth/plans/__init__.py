"""Registered queries; importing this package registers them all."""

from tilth.plans import discovery, flagship, rasters, registry, results, scenes

__all__ = ["discovery", "flagship", "rasters", "registry", "results", "scenes"]
