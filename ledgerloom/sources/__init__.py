"""Readers, writers and record layouts."""
