"""Readers, sinks, model bundles and the stand-in tables."""
