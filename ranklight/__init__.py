"""Recommendation and experiment analytics as lazy Spark jobs."""
