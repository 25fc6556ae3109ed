"""Operators for training-data corpora over ``documents``; nothing else imports this package."""
