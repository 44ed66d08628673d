"""Scans, uploads and readers of document formats."""
