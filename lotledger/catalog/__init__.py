"""Every operator as a runnable query over the given tables, with its SQL check."""

from __future__ import annotations

import importlib

FAMILIES = ("scans", "values", "rows", "reports", "errors", "splits", "models", "drift", "search", "policy", "service")


def load_all():
    """Import every family and return the registry."""
    for family in FAMILIES:
        importlib.import_module(f"{__name__}.{family}")
    return importlib.import_module(f"{__name__}.registry")
