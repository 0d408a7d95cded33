"""Readers and writers of text collections."""
