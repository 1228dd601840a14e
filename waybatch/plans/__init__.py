"""Whole jobs and the fixture views over the driver's tables."""
