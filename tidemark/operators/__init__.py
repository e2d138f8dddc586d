"""Operators of the inventory: counters, offsets, cells, paging, snapshots."""
