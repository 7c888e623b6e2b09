"""Registered queries: each reads the given tables and, where SQL can say it, has an SQL twin."""

import importlib

QUERIES = {}
ORACLES = {}

_MODULES = ("tables", "rows", "profiles", "encoding", "reduction", "splits", "neighbours", "models", "ensembles", "searching", "scoring", "flows")


def query(name, sql=None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load():
    for m in _MODULES:
        importlib.import_module(f"catalog.{m}")
    return QUERIES, ORACLES
