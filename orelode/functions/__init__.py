"""Part of the orelode engine."""
