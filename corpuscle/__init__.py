"""Semantic corpus analytics as Spark jobs."""
