"""Readers, writers, partition slices and completeness checks."""
