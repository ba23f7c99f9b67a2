"""Flat-file checking, splitting and reconciliation as Spark jobs."""
