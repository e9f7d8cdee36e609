"""Operators for preparing training data of language models; nothing else imports them."""
