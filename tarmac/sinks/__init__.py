"""Idempotent micro-batch sinks and payload encoders."""
