"""Imports every catalogue module so their queries register themselves."""

from __future__ import annotations

import importlib

from furrow.plans.catalog import ORACLE, QUERIES

_MODULES = [
    "furrow.plans.q_groups",
    "furrow.plans.q_rows",
    "furrow.plans.q_encode",
    "furrow.plans.q_eval",
    "furrow.plans.q_models",
    "furrow.plans.q_stream",
    "furrow.plans.q_sources",
]


def _load() -> None:
    for m in _MODULES:
        importlib.import_module(m)


def all_queries():
    _load()
    return dict(QUERIES)


def all_oracle_sql():
    _load()
    return dict(ORACLE)
