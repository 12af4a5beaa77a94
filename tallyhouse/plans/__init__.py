"""Whole queries over the layer tables."""
