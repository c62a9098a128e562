"""Operators for preparing large text corpora; ``queries`` binds them to the driver tables."""
