"""Registry of query keys: a Spark callable ``(spark, sf_dir) -> DataFrame``
and, where SQL can express it, the DuckDB oracle statement."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query key {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return wrap


def load_all() -> None:
    """Import every module that registers query keys."""
    from statlake.plans import checks, inputs, reads  # noqa: F401
