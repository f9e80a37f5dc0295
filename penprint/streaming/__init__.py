"""Scoring of text streams."""
