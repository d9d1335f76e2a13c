"""Operators for preparing training text at scale (the thirteen numbered operators).

Nothing else in the library imports this subpackage.
"""
