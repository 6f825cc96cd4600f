"""Composed jobs, each one lazy plan from scan to sink."""
