"""Relational operators over tiles, features, scores and labels."""
