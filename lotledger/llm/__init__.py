"""Operators for preparing training text, each behind a plain function over DataFrames.

``catalog`` registers one query per operator; nothing else in the library
imports this package.
"""
