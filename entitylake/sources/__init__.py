"""Readers, sinks, audit and shared-folder tables."""
