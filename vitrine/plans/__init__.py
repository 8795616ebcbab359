"""Layers, marts and operational reports."""
