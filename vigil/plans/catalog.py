"""Registry of named queries: name -> (spark, sf_dir) -> DataFrame, and the
matching DuckDB SQL when the operator is SQL-expressible."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def bigint_count_if(sql: str) -> str:
    """Wrap every ``count_if(...)`` in ``CAST(... AS BIGINT)``: DuckDB returns
    HUGEINT where Spark's ``count_if`` returns BIGINT."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len(key) - 1
        while True:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            if depth == 0:
                break
            k += 1
        out.append(sql[i:j])
        out.append("CAST(count_if(" + bigint_count_if(sql[j + len(key):k]) + ") AS BIGINT)")
        i = k + 1


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = bigint_count_if(sql)
        return fn

    return deco


def load_all() -> None:
    # importing the modules fills the registry
    from vigil.plans import (  # noqa: F401
        q_chains, q_corpus, q_events, q_layout, q_logs, q_quality, q_signals, q_sources, q_streams,
    )
