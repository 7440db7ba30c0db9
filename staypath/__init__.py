"""Retention analytics on Spark: event log in, features, labels, profiles and models out."""
