"""Operators for preparing training text, their registered queries and SQL twins."""

import importlib

QUERIES = {}
ORACLES = {}

_MODULES = ("bpe", "decontaminate", "sampling", "near_dups", "substrings", "surrogates", "language", "code_length", "extraction", "cotraining", "ranked_search", "prefix_trie", "toxicity")


def query(name, sql=None):
    """Register a query, with its SQL twin where SQL can say it."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load():
    for m in _MODULES:
        importlib.import_module(f"rowloom.llm.{m}")
    import corpus_pipeline

    QUERIES["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL is not None:
        ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
    return QUERIES, ORACLES
