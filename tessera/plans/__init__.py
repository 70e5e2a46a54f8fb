"""Whole plans: training, linking, resuming."""
