"""Listing files, event streams and stored datasets."""
