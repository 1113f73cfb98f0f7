"""Scans of landed data, table sinks and exports."""
