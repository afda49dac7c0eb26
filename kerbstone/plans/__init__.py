"""Whole-layer plans put together from the operators."""
