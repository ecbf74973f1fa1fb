"""Readers and writers of logs, stage tables and lookup tables."""
