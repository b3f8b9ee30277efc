"""Operators for preparing text corpora; see the module of each operator."""
