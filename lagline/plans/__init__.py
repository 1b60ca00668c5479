"""End-to-end runs: preparation, training, evaluation."""
