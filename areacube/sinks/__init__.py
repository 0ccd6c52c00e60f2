"""Cube bundle writers (SNK1-SNK4)."""
