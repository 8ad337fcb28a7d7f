"""Readers, writers and stored artefacts."""
