"""Reusable table operators (transforms, aggregates, windows, joins, selections)."""
