"""Operators for preparing language-model training data. Each module is one operator; nothing outside imports them."""
