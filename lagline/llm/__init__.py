"""Operators for training-data corpora: documents, pages and benchmarks in, decisions and counts out.

Conventions shared by all of them: columns the operator doesn't need are never touched, so extra
columns with any names do no harm; a null text is an empty text; rows equal in id and text are one
document; empty tables give empty results.
"""
