"""Readers, JSON shaping, load modes, schema evolution and upserts."""
