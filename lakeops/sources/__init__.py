"""Readers, writers and the shared staging area."""
