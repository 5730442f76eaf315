"""Readers and writers for the public files and the annual tables."""
