"""Flows put together from the operators."""
