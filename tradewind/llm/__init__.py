"""Operators for preparing training text at scale; nothing else imports them."""
