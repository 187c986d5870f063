"""Readers, element builders and the chunk store."""
