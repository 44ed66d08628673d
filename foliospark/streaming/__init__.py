"""Uploads and job states as streams."""
