"""Readers, writers and the star views (S*)."""
