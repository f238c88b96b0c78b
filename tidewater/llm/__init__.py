"""Operators for preparing training text: scoring, filtering, duplicate removal, tokens. See ``queries`` for the registered ones."""
