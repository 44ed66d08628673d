"""Parsing backends, runs, sinks and the command line."""
