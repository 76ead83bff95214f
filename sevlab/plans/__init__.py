"""End-to-end jobs, the test-table binding and the registered queries."""
