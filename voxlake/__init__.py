"""Voxel and embedding analytics as Spark DataFrame operations."""
