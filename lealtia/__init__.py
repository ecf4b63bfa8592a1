"""Loyalty-programme analytics written for Spark: reports, customer features, segments, purchase intensity."""
