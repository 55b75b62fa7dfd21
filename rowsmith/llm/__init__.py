"""Training-data pipeline operators.

A self-contained subpackage: nothing else in the library imports it, and it
imports nothing from the rest of the library.
"""
