"""Readers, writers and the analogue views over the test tables."""
