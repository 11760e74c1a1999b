"""Chains of operators."""
