"""Readers of the driver tables and the views derived from them (topic records, clicks, cells)."""
