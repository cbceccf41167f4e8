"""Readers, sinks and path rules."""
