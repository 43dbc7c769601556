"""Wiring: jobs over catalog tables and the registered queries."""
