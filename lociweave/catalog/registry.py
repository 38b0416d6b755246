"""All registered queries, by family."""

from __future__ import annotations

from . import spectra, sites, intervals, reads, synteny, files, stored  # noqa: F401
from .base import CHECKS, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def checks() -> dict[str, str]:
    return dict(CHECKS)
