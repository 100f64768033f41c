"""Readers, writers and guards."""
