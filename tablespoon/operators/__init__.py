"""Relational building blocks, each a function from frames to a frame."""
