"""Composed feature, training and exploration plans."""
