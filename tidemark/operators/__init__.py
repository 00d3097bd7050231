"""Transforms from one table to another; each works on any size and any skew."""
