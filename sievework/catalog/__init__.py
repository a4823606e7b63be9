"""The registered queries and their SQL twins."""

from __future__ import annotations

import importlib

MODULES = ("storing", "searching", "joining", "monitoring", "thresholds", "texts", "replies", "modelling", "streams")


def load():
    """(queries, oracles) of all catalog modules."""
    for name in MODULES:
        importlib.import_module(f"sievework.catalog.{name}")
    from sievework.catalog.base import ORACLES, QUERIES, shaped
    from sievework.catalog.results import RESULTS

    return dict(QUERIES), {name: shaped(sql, RESULTS[name]) for name, sql in ORACLES.items()}
