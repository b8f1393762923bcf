"""Inputs: the telemetry fixtures over the given tables, file landing zones, loads."""
