"""Readers of elements, changes and polygons."""
