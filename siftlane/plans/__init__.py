"""Registered queries of the reference-shaped operators."""
