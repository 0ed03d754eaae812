"""End-to-end questions: point, multi-point, transect and region queries."""
