"""Scans and sinks: page archives, frontiers, asset files, catalogue tables and run logs."""
