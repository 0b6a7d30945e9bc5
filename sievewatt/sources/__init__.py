"""Readers for raw files and the versioned tables the layers live in."""
