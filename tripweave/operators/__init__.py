"""Reusable DataFrame operators the datasets are made of."""
