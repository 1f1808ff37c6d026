"""Relationship-outreach analytics expressed as Spark DataFrame operators."""
