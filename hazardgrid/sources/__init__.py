"""Readers, writers and staging."""
