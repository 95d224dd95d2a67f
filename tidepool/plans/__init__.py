"""Registered queries over the test tables (one module per operator family)."""

from __future__ import annotations

from .registry import REGISTRY


def _load():
    # Importing the modules fills REGISTRY through the @register decorator.
    from . import relational, windows, nested, merges, changelogs, quality_checks  # noqa: F401
    from . import ingest, layouts, streams, pipelines, marts  # noqa: F401


def registry_dicts():
    _load()
    fns = {k: q.fn for k, q in REGISTRY.items()}
    oracles = {k: q.oracle for k, q in REGISTRY.items() if q.oracle}
    return fns, oracles
