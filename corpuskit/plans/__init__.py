"""End-to-end jobs and the registered driver queries."""
