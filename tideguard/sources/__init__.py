"""Readers, writers and dataset publishing."""
