"""Table, stream, JSON-event and result-file sources."""
