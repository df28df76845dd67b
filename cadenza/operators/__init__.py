"""Relational and analytical operators, each ``DataFrame -> DataFrame``."""
