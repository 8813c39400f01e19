"""End-to-end jobs and the catalogue of runnable queries."""
