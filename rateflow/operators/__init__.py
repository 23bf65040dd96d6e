"""Dimensions, aggregates, joins with defaults and the standardiser, as DataFrame functions."""
