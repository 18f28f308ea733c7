"""Clickstream and rewards analytics as Spark DataFrame plans."""
