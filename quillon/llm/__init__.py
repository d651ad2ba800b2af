"""Operators that prepare texts for the training of language models."""
