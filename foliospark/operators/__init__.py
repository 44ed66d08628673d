"""Relational operators of the ingestion engine."""
