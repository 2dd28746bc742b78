"""Operators for training-text problems; nothing outside this folder imports it."""
