"""All registered workloads and their oracle SQL, gathered by family."""

from __future__ import annotations

import importlib

FAMILIES = ("cdc", "joins", "merge", "ingest", "streams")


def _modules():
    return [importlib.import_module(f"ingestkit.workloads.{name}") for name in FAMILIES]


def all_queries():
    out = {}
    for mod in _modules():
        out.update(mod.QUERIES)
    return out


def all_oracles():
    out = {}
    for mod in _modules():
        out.update(mod.ORACLE)
    return out
