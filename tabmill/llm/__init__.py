"""Operators that prepare text, vectors, pages and conversations for training."""
