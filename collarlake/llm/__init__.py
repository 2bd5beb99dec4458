"""Operators for training data, each usable on its own; ``queries`` registers them."""
