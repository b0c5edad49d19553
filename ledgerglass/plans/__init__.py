"""End-to-end feature builds, evaluation runs and the query catalog."""
