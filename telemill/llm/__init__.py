"""Operators for preparing training text: sharding, mixing, deduplication, scoring.

Nothing else in the library imports this subpackage.
"""
