"""Operators for preparing training text: duplicates, contamination, classifiers, secrets, mixing."""
