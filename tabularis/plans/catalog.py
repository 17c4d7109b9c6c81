"""Catalogue of registered queries: name -> Spark plan, name -> DuckDB oracle text."""

from __future__ import annotations

import functools
import importlib

from tabularis.plans.common import QueryFn
from tabularis.session import ship

PLAN_MODULES = ("sales", "quality", "metrics", "profile", "prep", "recsys", "annotations", "cluster", "learners", "scoring", "columns", "files")


def _modules():
    return [importlib.import_module(f"tabularis.plans.{m}") for m in PLAN_MODULES]


def shipped(fn: QueryFn) -> QueryFn:
    """The query with the package sent to the workers first."""

    @functools.wraps(fn)
    def run(spark, sf_dir):
        ship(spark)
        return fn(spark, sf_dir)

    return run


def queries() -> dict[str, QueryFn]:
    out: dict[str, QueryFn] = {}
    for mod in _modules():
        out.update({name: shipped(fn) for name, fn in mod.QUERIES.items()})
    return out


def _bigint_counts(sql: str) -> str:
    """DuckDB types ``count_if`` as HUGEINT; Spark's ``count_if`` is BIGINT. Wrap every call."""
    out, i, token = [], 0, "count_if("
    while True:
        j = sql.find(token, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(token)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j] + "CAST(" + sql[j:k] + " AS BIGINT)")
        i = k


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for mod in _modules():
        out.update({k: _bigint_counts(v) for k, v in getattr(mod, "ORACLE", {}).items()})
    return out
