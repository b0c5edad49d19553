"""Row-local column expressions."""
