"""Scans and sinks: file listings, images, raw buffers, sample tables."""
