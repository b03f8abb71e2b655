"""Relational building blocks shared by batch and stream."""
