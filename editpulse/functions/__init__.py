"""Column-level helpers: parsing, validation and event-time arithmetic."""
