"""Mapping language: loading, validation and compilation to column expressions."""
