"""Participant identity, roster maintenance and clinical extracts on Spark DataFrames."""

__version__ = "0.1.0"
