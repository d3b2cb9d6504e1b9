"""Operators a training-data pipeline needs, one module each, and their queries.

Nothing else in the library imports this subpackage.  ``catalog`` maps the
registered query names to functions and, where SQL can express them, oracles.
"""
