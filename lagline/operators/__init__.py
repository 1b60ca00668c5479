"""Operators on DataFrames: cleaning, profiling, features, learning, evaluation."""
