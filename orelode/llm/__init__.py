"""Operators for training-data curation; nothing outside this subpackage imports it."""
