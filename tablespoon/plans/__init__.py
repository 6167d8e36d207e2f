"""Whole plans: the transformation, staging models, marts, and jobs."""
