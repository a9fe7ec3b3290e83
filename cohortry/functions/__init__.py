"""Scalar, array and distribution functions."""
