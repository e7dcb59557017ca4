"""Query keys of this package: ``(spark, sf_dir) -> DataFrame`` and DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from statlake.llm.frames import ship

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn):
        @wraps(fn)
        def run(spark, sf_dir):
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run
    return wrap
