"""Operators over element tables: reference resolution, table rows, generalisation, changes, tiles, lookups, sinks."""
