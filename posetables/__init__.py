"""Pose-dataset analytics as Spark DataFrame jobs."""
