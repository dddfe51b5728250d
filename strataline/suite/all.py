"""Loads every suite module, which registers its queries."""

from __future__ import annotations

from . import history, ingest, quality, recon, reports, star  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
