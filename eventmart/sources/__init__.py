"""Readers and writers: raw JSON files, catalog tables, the driver's test tables."""
