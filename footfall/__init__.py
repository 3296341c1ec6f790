"""Footfall: behavioural affinity and recommendations as Spark jobs."""
