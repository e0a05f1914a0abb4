"""Column-parameterised DataFrame operators (batch and streaming)."""
