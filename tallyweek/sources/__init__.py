"""Scans of landed files, source normalisation and sinks."""
