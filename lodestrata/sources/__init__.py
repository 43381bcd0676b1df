"""Scans, flat-file parsers and sinks."""
