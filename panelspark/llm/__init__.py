"""Operators for preparing language-model training data, and the pipeline's queries."""
