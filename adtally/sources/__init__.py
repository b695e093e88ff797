"""Readers of landed files and writers of catalog tables."""
