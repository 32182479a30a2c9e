"""Table, topic and replay sources."""
