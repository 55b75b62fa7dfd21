"""Grouped deals kept up to date from arriving rows."""
