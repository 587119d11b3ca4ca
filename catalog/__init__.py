"""The registered queries: every operator applied to the driver tables, each beside its SQL.

``load()`` imports the query modules, which register themselves.
"""

from __future__ import annotations

from .register import QUERIES, SQL


def load() -> tuple[dict, dict]:
    from . import cleaning, drift, features, ingest, models, quality, streams  # noqa: F401

    return dict(QUERIES), dict(SQL)
