"""Reading and writing corpora, metrics and models."""
