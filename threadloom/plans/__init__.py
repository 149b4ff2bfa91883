"""Registered queries: each one pairs a Spark plan with its SQL twin."""
