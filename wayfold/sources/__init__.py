"""Readers and writers for the trip-log files."""
