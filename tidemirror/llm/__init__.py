"""Operators that prepare documents and embeddings for training language models."""
