"""Readers: trip Parquet, zone vertices, delivery CSV folders."""
