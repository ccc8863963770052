"""Projections, and the life of the tables they are written to."""
