"""Matched-panel price data as Spark jobs: landing, quality gates, identity, links, indices and measures."""
