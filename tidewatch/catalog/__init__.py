"""Queries over the given tables, one or more per operator, with SQL equivalents."""

from __future__ import annotations

from tidewatch.catalog import collectors, delivery, identity, rules, scalars, shaping, streams
from tidewatch.catalog.base import Query

MODULES = (scalars, rules, collectors, identity, shaping, delivery, streams)


def entries() -> dict[str, Query]:
    return {name: query for module in MODULES for name, query in module.entries().items()}
