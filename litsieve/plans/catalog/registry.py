"""The query catalog: each query with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from litsieve.plans.catalog.views import Inputs, with_views

Body = Callable[[Inputs], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Body
    oracle: str | None


CATALOG: dict[str, Query] = {}


def query(name: str, oracle: str | None = None, ctes: dict[str, str] | None = None):
    """Register a query; ``oracle`` may name any view, ``ctes`` adds local ones."""

    def register(body: Body) -> Body:
        if name in CATALOG:
            raise ValueError(f"duplicate query {name}")
        CATALOG[name] = Query(body, with_views(oracle, ctes) if oracle else None)
        return body

    return register


def load() -> dict[str, Query]:
    from litsieve.plans.catalog import files, learning, reports, selection, text  # noqa: F401

    return CATALOG
