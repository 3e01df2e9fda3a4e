"""End-to-end plans, the fixtures they run on, and the query catalogue."""
