"""Scalar functions: text keys, identifiers, JSON and scoring expressions."""
