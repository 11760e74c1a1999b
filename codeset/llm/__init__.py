"""Operators of a training-data pipeline; nothing else imports this package."""
