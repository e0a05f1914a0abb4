"""Sampling, the MLlib delay pipeline and distributed evaluation."""
