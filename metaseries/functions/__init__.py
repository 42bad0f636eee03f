"""Scalar helpers: column expressions, quantiles, number and date forms."""
