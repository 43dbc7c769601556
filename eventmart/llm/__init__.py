"""Operators of a training-data pipeline, one module each; see the README for the methods."""
