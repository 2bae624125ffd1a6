"""Readers; everything returned is a lazy DataFrame."""
