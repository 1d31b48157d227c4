"""Registered queries: each operator on the canonical inputs, with the SQL it must agree with."""

from __future__ import annotations

from riskframe.queries import cleaning, explaining, modelling, profiling, shaping, tables

MODULES = (tables, cleaning, shaping, profiling, modelling, explaining)


def all_queries() -> dict:
    out = {}
    for module in MODULES:
        for name, (run, _) in module.QUERIES.items():
            if name in out:
                raise ValueError(f"Query {name} is registered twice")
            out[name] = run
    return out


def all_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, (_, sql) in module.QUERIES.items() if sql is not None}
