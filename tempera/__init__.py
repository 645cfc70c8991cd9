"""Mood-driven playlist analytics on Spark."""
