"""Readers of landed files and writers of landing files and tables."""
