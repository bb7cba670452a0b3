"""Operators for training-data corpora, each by a method of its own; nothing else imports this package."""
