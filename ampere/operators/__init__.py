"""Reusable, parameterised DataFrame operators (keys, order, window, threshold)."""
