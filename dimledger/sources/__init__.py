"""Readers, declared schemas and rerun-safe writers."""
