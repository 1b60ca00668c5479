"""Readers and writers: delimited files, prepared tables, fitted models."""
