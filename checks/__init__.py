"""Registered queries, their input views and their check SQL."""
