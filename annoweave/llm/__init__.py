"""Operators that prepare large collections for model training."""
