"""Scalar rules: canonical forms of observables, identifiers and names."""
