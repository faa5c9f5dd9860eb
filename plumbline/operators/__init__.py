"""Operators on panels: cells, links, indices, levels, coverage, gates and dimensions."""
