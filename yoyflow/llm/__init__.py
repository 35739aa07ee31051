"""Corpus operators for preparing training text; nothing else imports this package."""
