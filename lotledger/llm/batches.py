"""Sizes of the Arrow batches that tasks exchange with Python workers."""

from __future__ import annotations

from ..session import BATCH_BYTES as BYTES, BATCH_ROWS as ROWS, bound_batches as bound  # noqa: F401
