"""Corpus-level operators: DataFrame in, DataFrame out."""
