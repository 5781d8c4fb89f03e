"""Reusable physical-shape helpers: skew-proof windows, spatial tiles, components."""
