"""Whole jobs made of the operators, and the queries over the driver's tables."""
