"""Keeping tables up to date: partials by batch, keyed loads, refresh order."""
