"""Scans, staging, sinks and the test-table fixtures."""
