"""Table readers."""
