"""Scoring of streaming DataFrames."""
