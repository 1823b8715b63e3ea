"""Layered event and master-data processing as plain DataFrame operators on Spark."""
