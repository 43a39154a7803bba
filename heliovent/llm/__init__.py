"""Operators for preparing training data of language models; nothing else in the package imports this."""
