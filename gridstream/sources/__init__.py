"""Scans, decoders and sinks."""
