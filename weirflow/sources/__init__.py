"""Readers, schemas and writers."""
