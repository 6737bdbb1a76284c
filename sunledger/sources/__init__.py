"""Schemas, readers, payload parsers and sinks."""
