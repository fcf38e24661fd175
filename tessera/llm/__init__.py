"""Operators for preparing large text corpora (ten numbered operators and their helpers)."""
