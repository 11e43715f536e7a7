"""Readers: driver tables, bar construction, landed files, reshaping."""
