"""Readers. Every function takes the session first and returns a DataFrame."""
