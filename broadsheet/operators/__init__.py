"""Relational, matrix and model operators."""
