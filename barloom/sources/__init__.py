"""Readers, writers and reference lists."""
