"""Whole jobs: building the warehouse, checking it, reporting on it."""
