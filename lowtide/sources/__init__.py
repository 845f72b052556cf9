"""Readers, base-table builds, sinks and the mapping of the test tables."""
