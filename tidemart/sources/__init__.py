"""Readers: daily tables, delimited and key=value text, versioned config, relational snapshots."""
