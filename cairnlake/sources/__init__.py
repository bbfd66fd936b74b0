"""Batch scans, whole-file readers and message streams."""
