"""Everyday analytics operators on tables and streams, planned by Spark."""
