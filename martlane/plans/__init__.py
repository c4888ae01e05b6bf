"""Read-side query plans over the cleaned tables."""
