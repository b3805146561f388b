"""Readers and source specifications."""
