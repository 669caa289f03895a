"""Readers and writers: file manifests, grid stores, metadata, chunk files."""
