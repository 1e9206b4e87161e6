"""Readers: driver tables, CSV variants, JSON master data, state files, series."""
