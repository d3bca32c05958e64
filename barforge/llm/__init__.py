"""Operators that prepare training text: one module per operator.

Nothing else in the library imports this subpackage.
"""
